"""textoverlap: sentence-level text-overlap detection on Spark DataFrames.

Documents are split into sentences, sentences into byte shingles; sentence
pairs are found with exact, partitioned similarity joins (normalised edit
distance and shingle-set Jaccard) and rolled up to document-pair scores.
"""

from textoverlap.config import Params

__all__ = ["Params"]
