"""Record linkage of person and address rows as lazy Spark plans."""
