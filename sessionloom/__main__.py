"""python -m sessionloom"""

import sys

from sessionloom.cli import main

sys.exit(main())
