"""The three output tables and the jobs that publish them."""
