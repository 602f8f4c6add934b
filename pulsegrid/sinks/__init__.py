from pulsegrid.sinks.archive import *  # noqa: F401,F403
from pulsegrid.sinks.batch_table import *  # noqa: F401,F403
from pulsegrid.sinks.files import *  # noqa: F401,F403
from pulsegrid.sinks.metric_table import *  # noqa: F401,F403
