"""Parameters of the detector.

Fixed values that must equal the original tool's for equal results are kept
together here, in their natural form.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must match the original detector) -----------------------
# Sentence-ending characters; runs of them separate sentences.
SENTENCE_DELIMITERS = ".!?"
# Leading characters stripped from every sentence fragment.
LEADING_WHITESPACE = " \n\r\t"
# A sentence pair is similar when its similarity is >= this value.
SIMILARITY_THRESHOLD = 0.7
# A document pair is flagged when its overall similarity is >= this value.
PLAGIARISM_THRESHOLD = 0.5
# Shingle size in bytes.
SHINGLE_SIZE = 3
# Report lines.
REPORT_RULE = "----------------------------------------"
REPORT_TITLE = "Plagiarism Detection Report"
REPORT_POSITIVE = "PLAGIARISM DETECTED: These documents show significant similarity."
REPORT_NEGATIVE = "NO PLAGIARISM DETECTED: These documents do not show significant similarity."
# ---------------------------------------------------------------------------

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Modulus of the seeded affine permutations, a Mersenne prime: ids below it map injectively (every 3-byte shingle code,
# and the ids of any vocabulary below two billion shingles).
PERM_PRIME = 2147483647


@dataclass(frozen=True)
class Params:
    """Tunable knobs; defaults reproduce the original detector."""

    sim_threshold: float = SIMILARITY_THRESHOLD
    flag_threshold: float = PLAGIARISM_THRESHOLD
    k: int = SHINGLE_SIZE
    # MinHash signature length and seed (the original is unseeded).
    num_perm: int = 64
    seed: int = 20240601
    # LSH banding for approximate candidate generation; its signature has
    # bands * rows permutations (seeded like the dense vectors).
    bands: int = 20
    rows: int = 5
    # Target number of rows per block in blocked pair joins: each join task
    # compares at most block_rows**2 pairs, whatever the key skew.
    block_rows: int = 2048
    # Rows of one key from which a join with a one-row-a-key table deals the
    # key out over several tasks.
    salt_rows: int = 1 << 18

    def __post_init__(self):
        if not 1 <= self.k <= 7:
            raise ValueError("k must be 1 to 7: a shingle's bytes are one long")
