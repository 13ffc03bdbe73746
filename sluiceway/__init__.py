"""Landing streams of JSON records in analytical tables, with Spark."""

from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import *  # noqa: F401,F403
from .plans import __all__ as _plans
from .session import prepare_session
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources
from .streaming import *  # noqa: F401,F403
from .streaming import __all__ as _streaming

__all__ = [*_functions, *_operators, *_plans, *_sources, *_streaming, "prepare_session"]
