from tidemark.functions.columns import *  # noqa: F401,F403
from tidemark.functions.joins import clustered, lookup_join  # noqa: F401
