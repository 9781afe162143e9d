"""``python -m areacast ...`` runs the batch job (see areacast/plans/job.py)."""

from areacast.plans.job import main

main()
