"""Query plans: what the engine computes, from raw snapshots to reports."""
