"""haulframe: data preparation and reporting for freight-style tables on Apache Spark.

Every step is a plain function over a ``DataFrame``; Spark plans, shuffles and runs it.

* ``functions``  column expressions (text, numbers, dates, flags, staff rules)
* ``operators``  DataFrame steps (shaping, quality, joins, aggregates, windows, ordering, sets)
* ``sources``    readers, writers, managed tables, shared scratch folder
* ``plans``      named queries made of the above, each with its checking SQL
"""
