"""Imports every query module so that all named queries are registered."""

from . import q_index  # noqa: F401
from . import q_rules  # noqa: F401
from . import q_search  # noqa: F401
from . import q_corpus  # noqa: F401
from . import q_files  # noqa: F401
from . import q_components  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_cued  # noqa: F401
