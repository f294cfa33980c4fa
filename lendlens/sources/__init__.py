from lendlens.sources.fixtures import APPLICATIONS_SQL, APPS_CTES, oracle
from lendlens.sources.tables import (TABLES, applications, nan_to_null, read_applications,
                                     register_tables, table, write_table)

__all__ = ["APPLICATIONS_SQL", "APPS_CTES", "oracle", "TABLES", "applications", "nan_to_null",
           "read_applications", "register_tables", "table", "write_table"]
