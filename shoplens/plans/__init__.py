"""Multi-step jobs: the feature matrix and the full prediction run."""
