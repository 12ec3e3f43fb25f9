"""The layered pipeline: staging, analytics, reporting and upkeep."""
