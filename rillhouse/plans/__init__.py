"""The warehouse jobs on static input."""
