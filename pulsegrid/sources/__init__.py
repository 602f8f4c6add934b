from pulsegrid.sources.files import *  # noqa: F401,F403
from pulsegrid.sources.keyrange import *  # noqa: F401,F403
from pulsegrid.sources.messages import *  # noqa: F401,F403
from pulsegrid.sources.streams import *  # noqa: F401,F403
