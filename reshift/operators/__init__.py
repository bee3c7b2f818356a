"""DataFrame -> DataFrame operators of the job, one module per side of it."""
