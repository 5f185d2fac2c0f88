"""Importing this module fills the registry of the operators' queries."""

from fieldlens.llm import (chat, language, licenses, line_rules, line_windows, minmax, mixture, phrases,  # noqa: F401
                           quality, secrets, spaced_seeds, spelling, whitening)
from fieldlens.llm.common import ORACLES, QUERIES  # noqa: F401
