"""Operators that prepare text corpora for training: near duplicates, repeats, leaks, scoring, extraction, packing."""

import os

#: Spark runs a task per core; the small matrix products here gain nothing from threads of their own.
os.environ.setdefault("OMP_NUM_THREADS", "1")
