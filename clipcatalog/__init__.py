"""clipcatalog: a Spark-first engine that turns short-video captions and the
evidence around them into a scored, de-duplicated, servable catalog.

Sub-packages
------------
functions   ``Column -> Column`` building blocks (text, structured values, scores)
sources     readers, writers, vocabularies, keyed tables
operators   ``DataFrame -> DataFrame`` joins, upserts, roll-ups, rankings, serving
plans       the staged views, their checks and the batch run that chains them
streaming   event normalisation, stream-to-table sinks
queries     the registry behind ``__spark_entry__``
"""
