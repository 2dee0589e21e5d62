"""Model frames, classifiers, search, risk ranking, clustering and attribution on MLlib."""
