"""Check suites per stage and their summary."""
