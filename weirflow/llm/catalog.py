"""All registered queries of this folder and their oracles."""

from weirflow.llm import (
    collocations,
    decontamination,
    extraction,
    hard_negatives,
    language,
    mixing,
    packing,
    secret_scan,
    sharding,
    simhash,
    syncmers,
    token_counts,
    toxicity,
)
from weirflow.llm.common import plans

MODULES = (
    collocations,
    decontamination,
    extraction,
    hard_negatives,
    language,
    mixing,
    packing,
    secret_scan,
    sharding,
    simhash,
    syncmers,
    token_counts,
    toxicity,
)


def all_queries():
    return dict(plans.queries)


def all_oracles():
    return dict(plans.oracles)
