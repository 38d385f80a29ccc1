"""Dataset plans: staging, analytic models, history and the nightly run."""
