"""Binary decoding and data sources."""
