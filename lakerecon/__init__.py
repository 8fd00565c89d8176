"""Land event data in a lake, keep it well laid out, and prove that its copies agree."""

from .functions import *  # noqa: F401,F403
from .model import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .session import local_session, shared_dir
from .sinks import *  # noqa: F401,F403
from .sources import *  # noqa: F401,F403
from .streaming import *  # noqa: F401,F403
