"""Inputs: raw event schemas, readers, and the fixture derivation."""

from docsentinel.sources.schemas import RAW_CONTROLLED, RAW_CREATED  # noqa: F401
from docsentinel.sources.readers import read_raw_controlled, read_raw_created  # noqa: F401
