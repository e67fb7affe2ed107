"""Constants the tests share; a module of its own name, since several folders have a conftest."""

SMALL = "/root/testdata/sf0.001"
