"""faremeter: trip, listing and dispatch analytics as Spark DataFrame operators."""
