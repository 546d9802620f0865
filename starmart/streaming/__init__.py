"""The rules on arrivals as they come in."""
