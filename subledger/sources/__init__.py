from subledger.sources.bronze import BRONZE_COLUMNS, Bronze, load_csv, read_bronze, read_csv, write_bronze
from subledger.sources.fixtures import fixture_bronze

__all__ = ["BRONZE_COLUMNS", "Bronze", "fixture_bronze", "load_csv", "read_bronze", "read_csv", "write_bronze"]
