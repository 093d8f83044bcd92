"""The provided sample tables seen as risk data, and the checked queries over them."""
