"""DataFrame -> DataFrame building blocks shared by the models and queries."""
