"""pulsegrid: device, clinical and event analytics as Spark DataFrame operators."""
