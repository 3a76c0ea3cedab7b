"""Run-time helpers shared by operators: tables, materialised stages, bounded joins."""
