from shelfwise.sources.driver_tables import (  # noqa: F401
    read_table, cell_demand, build_products, build_panel,
)
