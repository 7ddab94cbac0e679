from .extract_stream import Extraction, extract_stream, run_extract, start_extract, stream_lines

__all__ = ["Extraction", "extract_stream", "run_extract", "start_extract", "stream_lines"]
