from marquee.sinks.tables import write_lines_to_topic, write_search_docs, write_table

__all__ = ["write_lines_to_topic", "write_search_docs", "write_table"]
