"""skymatch: catalogs of point detections on the sky, matched, kept and reported with Spark."""
