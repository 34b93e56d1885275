"""Privacy-safe, analysis-ready conversation and document datasets on Spark."""
