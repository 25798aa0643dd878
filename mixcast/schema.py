"""Column names, fixed category lists and declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for identical results.
CHANNELS = ["TV", "Radio", "Social_Media"]
CATEGORY = "Influencer"
CATEGORIES = ["Mega", "Macro", "Micro", "Nano"]  # first one is the dropped base level
TARGET_REG = "Sales"
TARGET_CLF = "Performance"
CLASSES = ["Low", "Medium", "High"]  # tercile labels, in order
REG_MODEL_NAMES = ["Linear Regression", "Random Forest", "Gradient Boosting", "MLP (Deep Learning)"]
CLF_MODEL_NAMES = ["Logistic Regression", "Random Forest", "Gradient Boosting", "MLP (Deep Learning)"]
DEFAULT_MODEL = "Gradient Boosting"
SEED = 42
KEY = "campaign_id"

# Display labels of features (dashboard wording, English codes).
FEATURE_LABELS = {"TV": "TV budget", "Radio": "Radio budget", "Social_Media": "Social Media budget"}

# Static deployment table of the reference (values as published).
DEPLOYMENT_COMPLEXITY = [
    # model, params_est, inference_ms, export, note
    ("Linear Regression", "~6", "< 1", "joblib / ONNX", "ideal for production"),
    ("Logistic Regression", "~18", "< 1", "joblib / ONNX", "ideal for production"),
    ("Random Forest", "~200k", "1–5", "joblib", "acceptable"),
    ("Gradient Boosting", "~20k", "1–3", "joblib / ONNX", "recommended"),
    ("MLP (Deep Learning)", "~24k", "1–5", "joblib / ONNX", "acceptable"),
]

CAMPAIGN_CSV_SCHEMA = T.StructType([
    T.StructField("TV", T.DoubleType()),
    T.StructField("Radio", T.DoubleType()),
    T.StructField("Social Media", T.DoubleType()),
    T.StructField("Influencer", T.StringType()),
    T.StructField("Sales", T.DoubleType()),
])

RAW_CAMPAIGN_SCHEMA = T.StructType([
    T.StructField(KEY, T.LongType(), False),
    T.StructField("TV", T.DoubleType()),
    T.StructField("Radio", T.DoubleType()),
    T.StructField("Social_Media", T.DoubleType()),
    T.StructField("Influencer", T.StringType()),
    T.StructField("Sales", T.DoubleType()),
])

SCENARIO_SCHEMA = T.StructType([
    T.StructField("TV", T.DoubleType()),
    T.StructField("Radio", T.DoubleType()),
    T.StructField("Social_Media", T.DoubleType()),
    T.StructField("Influencer", T.StringType()),
    T.StructField("model", T.StringType()),
])

MODEL_RUN_SCHEMA = T.StructType([
    T.StructField("task", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("tuned", T.BooleanType(), False),
    T.StructField("cv_scores", T.ArrayType(T.DoubleType())),
    T.StructField("cv_mean", T.DoubleType()),
    T.StructField("cv_std", T.DoubleType()),
    T.StructField("train_time_s", T.DoubleType()),
    T.StructField("n_params", T.LongType()),
    T.StructField("complexity", T.StringType()),
    T.StructField("path", T.StringType()),
])
