"""DataFrame -> DataFrame operators, used through ``df.transform``."""
