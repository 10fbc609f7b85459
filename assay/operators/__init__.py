"""DataFrame -> DataFrame operators shared by every feed."""
