"""The two end-to-end predictions: raw training and test rows in, submission and scores out."""
