"""``python -m consolida``."""

import sys

from consolida.cli import main

sys.exit(main())
