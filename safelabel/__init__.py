"""safelabel: building and evaluating multilingual text-safety tables on Spark.

Every operator is a DataFrame -> DataFrame function (``operators``), every scalar
rule is a Column expression (``functions``), and ``plans`` strings them into the
three end-to-end jobs.  Nothing keeps global state and nothing collects rows.
"""

__version__ = "0.1.0"
