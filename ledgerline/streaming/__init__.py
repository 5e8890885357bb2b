"""Live views over Structured Streaming; each view also runs on a batch frame."""
