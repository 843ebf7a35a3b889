"""The 14 mart tables and the job that builds them."""
