"""The fund-data plans: merge, staging, marts, questions, the weekly run."""
