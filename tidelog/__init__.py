"""Change-data-capture streams on Spark: parse, route, batch, checkpoint, measure."""
