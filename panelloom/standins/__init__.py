"""The driver tables seen as a fund panel, as workbooks and as sheets."""
