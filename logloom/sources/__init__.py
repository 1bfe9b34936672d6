"""File sources."""
