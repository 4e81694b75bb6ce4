"""bazaarlake: marketplace analytics as pure DataFrame -> DataFrame functions on Spark."""
