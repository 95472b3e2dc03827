"""keelson: Spark-native data work around predictive models.

Scans and input checks, missing-value handling, feature transforms, seeded exact
splits, scaling, column profiling, time bars and sequence windows, model fitting
and scoring, evaluation metrics, run/model-version tables and a streaming
forecast loop.  Every operator takes and returns Spark DataFrames.
"""

__version__ = "0.1.0"
