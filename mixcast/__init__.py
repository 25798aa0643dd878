"""mixcast: campaign-mix analytics on Spark.

Campaign tables (three channel budgets, an influencer tier, sales) are read,
cleaned, enriched, profiled, split, modelled, explained and scored as Spark
DataFrame jobs.  Every public function maps DataFrame -> DataFrame (or to a
fitted ``PipelineModel``) and never brings data rows to the driver; the only
values that reach the driver are bounded scalars (counts, quantile brackets,
model coefficients).
"""

__version__ = "0.1.0"
