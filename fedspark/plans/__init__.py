"""What a query could run at the remote: remote SQL and the reasons why a part stays local."""

from .remote_sql import Shipped, explain_scan, join_sql, order_sql, scan_sql, ship, split_filter

__all__ = ["Shipped", "explain_scan", "join_sql", "order_sql", "scan_sql", "ship", "split_filter"]
