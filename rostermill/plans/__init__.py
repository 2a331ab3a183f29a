"""The loads and backfills, composed of operators."""
