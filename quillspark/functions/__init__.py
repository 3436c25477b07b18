from quillspark.functions.text import *  # noqa: F401,F403
from quillspark.functions.text import __all__  # noqa: F401
