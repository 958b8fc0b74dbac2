from corpreg.functions.names import (
    blank,
    canonical_name,
    corporate_id,
    first_token,
    normalized_name,
)

__all__ = ["blank", "canonical_name", "corporate_id", "first_token", "normalized_name"]
