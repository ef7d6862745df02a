"""Claims and survey-microdata analytics expressed as Spark DataFrame transformations."""
