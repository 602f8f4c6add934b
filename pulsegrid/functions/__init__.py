from pulsegrid.functions.scalars import *  # noqa: F401,F403
from pulsegrid.functions.vectors import *  # noqa: F401,F403
