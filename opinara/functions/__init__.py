from opinara.functions.columns import (
    epoch_date,
    hash_bucket,
    intensity,
    is_target,
    label_value,
    link_key,
    parse_date,
    positive_probability,
    rate_diff,
    title_matches,
)
from opinara.functions.text import combined, ngrams, normalise, tokens, unigrams, word_tokens

__all__ = [
    "combined",
    "epoch_date",
    "hash_bucket",
    "intensity",
    "is_target",
    "label_value",
    "link_key",
    "ngrams",
    "normalise",
    "parse_date",
    "positive_probability",
    "rate_diff",
    "title_matches",
    "tokens",
    "unigrams",
    "word_tokens",
]
