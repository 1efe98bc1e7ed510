"""fedspark: external tables as lazy, typed DataFrames, planned and run by Spark."""

from .model import Column, ForeignTable, Server, UserMapping, Wrapper
from .session import Session

__all__ = ["Column", "ForeignTable", "Server", "Session", "UserMapping", "Wrapper"]
