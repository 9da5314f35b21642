from tallywire.functions.scalar import *  # noqa: F401,F403
