import sys

from tidewire.cli import main

sys.exit(main())
