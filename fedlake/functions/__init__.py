"""Column builders: strings, numbers, dates, booleans/enums/codes."""

from .strings import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
from .dates import *  # noqa: F401,F403
from .codes import *  # noqa: F401,F403
