"""Named queries (posture, reports), stand-in inputs and the registered suite."""
