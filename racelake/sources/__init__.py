"""Landing JSON pages -> typed raw tables (explicit schemas, from_json + explode)."""
