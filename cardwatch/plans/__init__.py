"""Multi-step jobs: preprocessing, training, ensembles, the whole run."""
