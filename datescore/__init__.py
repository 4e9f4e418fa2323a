"""datescore: candidate-date scoring, training and evaluation as Spark jobs.

Subpackages: ``sources`` (tables, files, models), ``functions`` (column
expressions), ``operators`` (sampling, metrics, ensembles, models, tuning),
``plans`` (jobs and registered queries), ``streaming`` (the daily job on new
days). See README.md.
"""

__version__ = "0.1.0"
