"""Training-data operators: joins, scans, classifiers, search and mixing over documents at scale."""
