from ranklens.streaming.run_stream import evaluate_run_stream, parse_run_lines  # noqa: F401
