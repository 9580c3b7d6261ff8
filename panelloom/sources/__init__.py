"""Reading: landed sheet rows, dated snapshots, the dataset registry."""
