from quillspark.streaming.text_stream import stream_tokens, stream_word_counts  # noqa: F401
