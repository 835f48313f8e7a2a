"""End-to-end plans: the motorsport jobs and the query set that re-aims
every operator at the driver's tables (see ``registry``)."""
