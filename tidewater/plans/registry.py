"""All registered queries (importing the modules fills the registry)."""

from tidewater.plans import queries as _core  # noqa: F401
from tidewater.plans import queries_io as _io  # noqa: F401
from tidewater.plans import queries_metrics as _metrics  # noqa: F401
from tidewater.plans import queries_ops as _ops  # noqa: F401
from tidewater.plans import queries_state as _state  # noqa: F401
from tidewater.plans import queries_stream as _stream  # noqa: F401
from tidewater.plans.queries import ORACLES, QUERIES  # noqa: F401
