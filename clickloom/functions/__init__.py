"""Column functions: URLs, channels, user agents, payloads and time."""
