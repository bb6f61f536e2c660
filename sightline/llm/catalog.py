"""All queries of the subpackage."""

from sightline.llm import decontaminate, gridjoin, licenses, mixing, multiset, pii, prefixtrie, quality, simhash, tokenfiles, tokens, toxicity, whitening  # noqa: F401
from sightline.llm.registry import ORACLES, QUERIES  # noqa: F401
