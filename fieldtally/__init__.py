"""Survey-event analytics on Spark: participation, species lists, roll-ups and reports."""
