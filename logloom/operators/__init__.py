"""DataFrame operators: framing, batching, snapshots, checkpoints, metrics."""
