"""Point-location features, spatial folds, stacking and prediction checks as Spark plans."""
