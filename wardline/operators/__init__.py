"""DataFrame -> DataFrame operators (cohort, timeline, text, features,
sampling, metrics, topics, classifiers)."""
