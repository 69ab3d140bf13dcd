"""tidemark: event-stream and event-sourcing operators as Spark DataFrame functions."""
