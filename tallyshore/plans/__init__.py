"""Reports, models and jobs built from the operators."""
