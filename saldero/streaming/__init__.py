"""The scheduled load as a stream that drains and stops."""
