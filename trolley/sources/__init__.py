from trolley.sources.tables import read_table, TABLES
from trolley.sources.adapter import lines, products, transactions, event_lines

__all__ = ["read_table", "TABLES", "lines", "products", "transactions", "event_lines"]
