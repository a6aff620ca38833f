"""Values shared by the tests of this folder."""

SF_DIR = "/root/testdata/sf0.001"
