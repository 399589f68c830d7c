"""Column functions (scalar rules) and SQL-callable macros."""
from .clinical import *  # noqa: F401,F403
