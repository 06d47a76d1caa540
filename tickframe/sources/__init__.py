from tickframe.sources.messages import kafka_options, parse_documents, read_documents, read_messages, stream_messages
from tickframe.sources.sinks import encode_messages, finish_swaps, staged_overwrite, write_messages, write_partitioned
from tickframe.sources.tables import empty_table, preview, read_layouts, read_table

__all__ = [
    "empty_table",
    "encode_messages",
    "finish_swaps",
    "kafka_options",
    "parse_documents",
    "preview",
    "read_documents",
    "read_layouts",
    "read_messages",
    "read_table",
    "staged_overwrite",
    "stream_messages",
    "write_messages",
    "write_partitioned",
]
