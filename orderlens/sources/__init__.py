from orderlens.sources import csv, views

__all__ = ["csv", "views"]
