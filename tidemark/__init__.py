"""tidemark: snapshot-and-change-log replication as Spark DataFrame operators."""

__version__ = "0.1.0"
