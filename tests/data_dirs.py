"""Where the driver's tables lie. A plain module: ``conftest`` is never imported by name."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
