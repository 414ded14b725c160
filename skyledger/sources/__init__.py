from skyledger.sources.readers import JdbcSource, SourceConfig, TableSource, read_sources

__all__ = ["JdbcSource", "SourceConfig", "TableSource", "read_sources"]
