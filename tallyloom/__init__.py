"""Customer sales analytics as Spark DataFrame jobs.

``functions``  Column in, Column out
``sources``    typed readers and the targets the jobs write to
``operators``  DataFrame in, DataFrame out; ``operators.sinks`` is the only part that writes
``plans``      the complete daily and monthly jobs
``checks``     the registered queries and the SQL they are compared with
"""
