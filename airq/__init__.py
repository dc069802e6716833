"""airq package."""
