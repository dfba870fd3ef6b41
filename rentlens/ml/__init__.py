"""Features, models, evaluation and scoring."""
