"""Import every catalogue module so all query keys are registered."""

from accounthealth.plans import catalog_models  # noqa: F401
from accounthealth.plans import catalog_quality  # noqa: F401
from accounthealth.plans import catalog_reports  # noqa: F401
from accounthealth.plans import catalog_workspace  # noqa: F401
from accounthealth.plans import catalog_explorer  # noqa: F401
