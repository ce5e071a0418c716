"""Training-data operators: secret scans, personal data, similarity joins,
decontamination, classifiers, URL rules, packing, nearest neighbours,
sampling and sharding. Nothing else in the library imports this package."""
