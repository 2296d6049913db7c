"""DataFrame -> DataFrame operators of the domain."""
