"""All registered queries of the subpackage."""

from . import alignment, chat, decontaminate, hosts, licenses, mixing, pii, sharding, simhash, toxicity, urls, warc, whitening  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
