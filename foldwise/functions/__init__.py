from foldwise.functions.common import (  # noqa: F401
    hash_key,
    ratio,
    rnd,
    to_features,
)
