"""The five daily tables, their corrections, and the reports on them."""
