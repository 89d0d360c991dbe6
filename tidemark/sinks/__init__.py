"""Writers.  Batch writers are idempotent per partition; stream writers rely
on a checkpoint (file sinks: exactly once) or a deterministic id."""
