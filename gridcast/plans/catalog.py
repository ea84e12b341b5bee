"""Import every query module so their ``@query`` registrations run."""

from . import q_core  # noqa: F401
from . import q_sources  # noqa: F401
from . import q_time  # noqa: F401
from . import q_joins  # noqa: F401
from . import q_aggs  # noqa: F401
from . import q_windows  # noqa: F401
from . import q_scalar  # noqa: F401
from . import q_model  # noqa: F401
from . import q_masters  # noqa: F401
from . import q_diag  # noqa: F401
from . import q_walk  # noqa: F401
