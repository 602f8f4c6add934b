from pulsegrid.streaming.batches import *  # noqa: F401,F403
from pulsegrid.streaming.ledger import *  # noqa: F401,F403
from pulsegrid.streaming.panel import *  # noqa: F401,F403
from pulsegrid.streaming.reports import *  # noqa: F401,F403
from pulsegrid.streaming.runs import *  # noqa: F401,F403
from pulsegrid.streaming.totals import *  # noqa: F401,F403
from pulsegrid.streaming.windows import *  # noqa: F401,F403
