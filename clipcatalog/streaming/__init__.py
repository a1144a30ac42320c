"""Detection events: normalisation, publishing, stream-to-table sinks."""
