"""millrace: contract-driven ingestion and support-ticket analytics as Spark DataFrame jobs."""

from millrace.contract import ColumnRule, ContractBook, FileContract
from millrace.session import lake_session, scratch_path, shared_root

__all__ = ["ColumnRule", "ContractBook", "FileContract", "lake_session", "scratch_path", "shared_root"]
