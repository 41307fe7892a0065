"""Social-account analytics as Spark DataFrame operators.

Sub-packages:

* ``functions`` - column expressions (ratios, dates, nested data, JSON)
* ``operators`` - DataFrame -> DataFrame operators
* ``sources``   - batch readers and writers
* ``streaming`` - Structured Streaming forms of ingest
* ``plans``     - whole jobs, test-table bindings and the query catalogue
"""
